"""Row-level expressions: parsing, derived columns, row rules, display texts."""
