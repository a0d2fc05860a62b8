"""Writers; all overwrite."""
