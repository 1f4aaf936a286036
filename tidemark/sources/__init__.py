"""Source readers, landing (bronze) and the fixture adapter."""
