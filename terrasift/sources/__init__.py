"""Landing-file readers and table writers."""
