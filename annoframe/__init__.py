"""Spark jobs for computer-vision dataset tables and detection streams."""
