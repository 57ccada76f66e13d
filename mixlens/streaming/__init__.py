"""Continuous intake of late and corrected rows."""
