"""Stand-in feeds, registered queries and their SQL twins, used to check the operators."""
