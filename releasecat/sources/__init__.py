"""Sources: release dumps, catalog tables and file listings."""
