"""Tables, control tables and the mapping of raw tables to bronze entities."""
