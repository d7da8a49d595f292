"""Writers for the output formats. Each writes a directory, in parallel."""
