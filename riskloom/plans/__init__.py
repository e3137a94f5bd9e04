"""The credit feature catalogue, the end-to-end run and the registered checks."""
