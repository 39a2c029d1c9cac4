"""Jobs a user calls, and the registered queries."""
