"""Reading landed files and reading and writing the library's tables."""
