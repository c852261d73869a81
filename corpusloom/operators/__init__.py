"""DataFrame operators over manifests, vectors and the catalog."""
