"""DataFrame-to-DataFrame operators of the layers."""
