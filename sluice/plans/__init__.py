"""Table specifications, processors, publication, derived features and the registered queries."""
