"""Column functions; none of them shuffles."""
