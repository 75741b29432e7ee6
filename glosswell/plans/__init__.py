"""The three questions asked of the comment stream, and the operational reports beside them."""
