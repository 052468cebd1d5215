"""The assembled run and the registered queries."""
