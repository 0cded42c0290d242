"""Readers of manifests, annotations, options and images, and synthetic scenes."""
