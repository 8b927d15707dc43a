"""Query plans: bindings of the operators to the driver's tables, the query
catalog, and the end-to-end runs (daily intake, scoring backlog, relabel)."""
