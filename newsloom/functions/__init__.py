"""Column functions: text, markup, addresses, ids, dates and numbers."""
