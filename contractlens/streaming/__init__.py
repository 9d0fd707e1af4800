"""Restartable loading of new pages and departments."""
