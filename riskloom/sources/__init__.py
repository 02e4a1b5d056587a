"""Reading, writing, generating and assembling labelled tables."""
