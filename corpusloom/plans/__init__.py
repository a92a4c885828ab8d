"""Registered queries by topic; each module offers QUERIES and ORACLE."""
