"""Reading and writing of files, documents and messages."""
