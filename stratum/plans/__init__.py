"""Stage builders: silver, gold, marts, pipeline, table adapter."""
