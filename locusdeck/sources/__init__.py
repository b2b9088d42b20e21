"""Readers: path manifests, archives, VCF and expression files, usage metrics, stored tables."""
