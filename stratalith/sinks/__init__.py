"""Writers whose outputs carry their own digests."""
