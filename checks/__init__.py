"""Every operator as a query over the test star, each with its SQL counterpart."""
