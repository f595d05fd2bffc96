"""Readers: landed JSON payloads (S1-S4) and lake tables."""
