"""Workspace planning, builds and publication."""
