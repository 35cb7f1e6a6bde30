"""Writers of published datasets and their table declarations."""
