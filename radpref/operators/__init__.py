"""Operators over frames of events: each adds columns, none shuffles."""
