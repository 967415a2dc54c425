"""Along-track and gridded sea-level analytics as DataFrame operators."""
