"""Stateful jobs over frames that arrive in order."""
