"""Readers and writers of the tables this engine works on."""
