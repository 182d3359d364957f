"""Operators for preparing training corpora, their queries and the SQL that checks them."""
