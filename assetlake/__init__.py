"""DataFrame operators for integration-platform asset metadata."""
