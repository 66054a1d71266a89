"""Everything that reads or writes outside the session."""
