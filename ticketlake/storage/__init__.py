"""Where merged tables live."""
