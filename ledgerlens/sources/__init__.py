"""Sources: raw test tables and the schemas the reports query."""
