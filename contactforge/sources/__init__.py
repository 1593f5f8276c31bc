"""Readers for delimited tables, member lists, coordinate text and interface XML."""
