"""Readers of landed files and stored tables, and generated calendars."""
