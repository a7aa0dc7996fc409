"""DataFrame operators. Plain ones map a frame to a frame; fitted ones return an object with ``apply``."""
