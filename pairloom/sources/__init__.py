"""Tables, directories and JSON Lines files."""
