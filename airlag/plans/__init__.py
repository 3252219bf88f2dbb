"""Stage order, registered queries and their SQL twins."""
