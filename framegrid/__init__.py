"""Part of framegrid."""
