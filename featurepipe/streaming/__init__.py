"""Structured Streaming forms of the feature view refresh and the window monitor."""
