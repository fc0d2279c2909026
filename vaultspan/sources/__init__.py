"""Raw tables, their files and the state they are merged into."""
