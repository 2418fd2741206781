"""Readers: symbol listings, source text, XML, manifests and configuration."""
