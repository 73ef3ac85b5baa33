"""Readers for landing files and server logs."""
