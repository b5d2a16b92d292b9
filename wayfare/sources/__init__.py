"""Reading raw files and writing layers."""
