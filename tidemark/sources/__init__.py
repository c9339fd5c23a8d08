"""Reading raw text files, loading them once, writing layers."""
