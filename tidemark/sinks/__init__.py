"""Writers: overwrite, append, partitioned, schema-merging, upsert, publish."""
