"""Writers: partitioned tables, window replacement, feature tables."""
