"""Tables, files and views."""
