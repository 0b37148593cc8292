"""Readers for stored and streamed input."""
