"""Reading and writing tables, and how they are laid out on disk."""
