"""Column-level helpers: rounding, clipping, flags, labels, hexagonal grid."""
