"""Reading and writing flow files, and listing them."""
