"""Plans: the layered medallion build and its sinks."""
