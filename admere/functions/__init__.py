"""Column functions: cleaning, keys, money, dates, URLs, JSON and rule features."""
