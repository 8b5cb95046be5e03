"""Table operators: reshape, ordered series, summaries, transforms, flow models, checks."""
