"""Column functions: identities, hashes, canonical JSON, text."""
