"""Tables of the pipeline: staging, conformed, star schema, value model, marts, monitoring."""
