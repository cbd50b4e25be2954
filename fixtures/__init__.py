"""Views that turn the given test tables into the library's inputs, and oracle SQL."""
