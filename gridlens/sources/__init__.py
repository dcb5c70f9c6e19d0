"""Feed normalisation and the append-log store."""
