"""DataFrame -> DataFrame operators, usable on batch and streaming frames."""
