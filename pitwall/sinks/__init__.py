"""Writers of raw tables and marts."""
