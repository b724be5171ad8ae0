"""Readers (corpus scans, stage reuse) and writers (report sinks)."""
