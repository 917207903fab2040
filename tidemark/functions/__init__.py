"""Column functions: key predicates, value codecs and extended JSON."""
