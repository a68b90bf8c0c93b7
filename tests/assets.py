"""Asset metadata for tests."""

# The asset metadata the warehouse ships with.
DEFAULT_ASSETS = [
    {"coin_id": "bitcoin", "symbol": "BTC", "name": "Bitcoin",
     "categories": "['Cryptocurrency', 'Layer 1']", "genesis_date": "2009-01-03",
     "hashing_algorithm": "SHA-256"},
    {"coin_id": "ethereum", "symbol": "ETH", "name": "Ethereum",
     "categories": "['Cryptocurrency', 'Smart Contract']", "genesis_date": "2015-07-30",
     "hashing_algorithm": "Ethash"},
    {"coin_id": "solana", "symbol": "SOL", "name": "Solana",
     "categories": "['Cryptocurrency', 'Layer 1']", "genesis_date": "2020-03-16",
     "hashing_algorithm": "PoH"},
]
