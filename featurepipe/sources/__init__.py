"""Sources (table scans, role mappings) and sinks (overwrite, append, versioned)."""
