"""DataFrame -> DataFrame operators of the fulfilment analyses."""
