"""Column functions: academic calendar, date parsing, decodes, validity rules."""
