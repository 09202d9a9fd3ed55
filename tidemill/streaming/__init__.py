"""The daily load as a stream that takes up what is new and stops."""
