"""Parameters, schemas and composed pipelines."""
