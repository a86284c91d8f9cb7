"""Readers: files, landed API payloads, message topics; and the specs that name them."""
