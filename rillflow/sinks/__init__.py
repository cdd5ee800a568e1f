"""Writers: topics, keyed day tables, files, JDBC tables."""
