"""Table builders, marts, dashboards and scoring jobs composed from the operators."""
