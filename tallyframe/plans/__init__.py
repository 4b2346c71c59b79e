"""Query plans on the test bed: the base mapping, the registry and the SQL oracle."""
