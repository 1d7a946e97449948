"""Stand-in roles, registered queries and their SQL twins on the driver tables."""
