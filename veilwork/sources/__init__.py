"""Reading file drops, tables and labelled data; writing tables."""
