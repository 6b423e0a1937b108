"""Readers, the source manifest, the sample store and report writers."""
