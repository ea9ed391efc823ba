"""DataFrame operators over usage records."""
