"""DataFrame -> DataFrame operators of the customer-360 model."""
