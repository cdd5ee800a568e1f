"""Readers: files, topics, JDBC tables, wide-column and hash stores, day tables."""
