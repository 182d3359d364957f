"""Row and group operators: versions, windows, joins, identity, sessions, checks."""
