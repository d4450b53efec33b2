"""Ready-made plans: configurations of the generic operators for the transfer schema."""
