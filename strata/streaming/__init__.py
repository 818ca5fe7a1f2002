"""Starting, watching and chaining streaming queries."""
