"""Writers with replace-by-key semantics."""
