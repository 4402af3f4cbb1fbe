"""Training-data operators over documents, pages and vectors; nothing else in the library imports them."""
