"""Rooms-on-books and room-night reporting as Spark DataFrame plans."""
