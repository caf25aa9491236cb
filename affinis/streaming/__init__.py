"""Stateless steps over streams of records."""
