"""DataFrame-to-DataFrame operators. They are lazy and run no action themselves."""
