"""Jobs, derived views and the registered queries."""
