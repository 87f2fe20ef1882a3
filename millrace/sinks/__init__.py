"""Writers: files, tables, loads that may be repeated, layout rewrites."""
