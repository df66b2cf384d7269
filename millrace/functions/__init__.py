"""Column functions: declared types, partition keys, number tests, text clean-up."""
