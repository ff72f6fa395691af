"""Incremental processing of a catalogue."""
