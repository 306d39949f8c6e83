"""Lazy DataFrame operators. None of them logs a count or brings trips to the driver."""
