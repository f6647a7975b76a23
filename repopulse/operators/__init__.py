"""DataFrame-to-DataFrame transforms, shared by batch and stream."""
