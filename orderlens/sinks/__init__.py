"""Sinks: lake, topic and console streams; catalog tables, views and DDL."""
