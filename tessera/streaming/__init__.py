"""Pushing files as they land in a folder."""
