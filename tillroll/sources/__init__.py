"""Reading invoice lines and writing result tables."""
