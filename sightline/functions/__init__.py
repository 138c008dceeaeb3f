"""Column functions: text, URLs, dates and addresses, and the vocabularies they are given."""
