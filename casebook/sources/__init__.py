"""Readers: driver tables, fixture documents, JSON document tables, text logs, paged feeds."""
