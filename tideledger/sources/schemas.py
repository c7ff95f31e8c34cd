"""Row shapes of the canonical tables and of the API records."""

from __future__ import annotations

CANONICAL_COLUMNS = (
    "bridge", "id",
    "from_date", "from_tx_hash", "from_chain_id", "from_chain_name", "from_user_address",
    "from_token_address", "from_token_symbol", "from_amount", "from_amount_usd",
    "to_date", "to_tx_hash", "to_chain_id", "to_chain_name", "to_user_address",
    "to_token_address", "to_token_symbol", "to_amount", "to_amount_usd",
    "relay_symbol", "relay_amount", "relay_amount_usd",
    "gas_symbol", "gas_amount", "gas_amount_usd",
)

CANONICAL_TYPES = {
    c: (
        "timestamp" if c.endswith("_date")
        else "bigint" if c.endswith("chain_id")
        else "double" if "amount" in c
        else "string"
    )
    for c in CANONICAL_COLUMNS
}

TOKEN = "struct<address:string,chainId:bigint,symbol:string,decimals:int,name:string,priceUSD:string>"
COST = f"struct<name:string,amount:string,amountUSD:string,token:{TOKEN}>"

# aggregator A: routes with steps
ROUTE_DOCUMENTS = (
    "payload struct<fromChainId:bigint,toChainId:bigint,fromAmount:string,fromTokenAddress:string,toTokenAddress:string>, "
    "routes array<struct<id:string,fromChainId:bigint,toChainId:bigint,fromAmountUSD:string,toAmountUSD:string,"
    "gasCostUSD:string,fromAmount:string,toAmount:string,tags:array<string>,"
    f"fromToken:{TOKEN},toToken:{TOKEN},"
    "steps:array<struct<id:string,type:string,tool:string,toolDetails:struct<key:string,name:string>,"
    f"estimate:struct<fromAmount:string,toAmount:string,feeCosts:array<{COST}>,gasCosts:array<{COST}>>>>>>, "
    "unavailableRoutes struct<failed:array<struct<overallPath:string,subpaths:string>>>"
)

# aggregator B: one result with quotes, user transactions and steps
QUOTE_DOCUMENTS = (
    "payload struct<fromChainId:bigint,toChainId:bigint,fromAmount:string,fromTokenAddress:string,toTokenAddress:string>, "
    "result struct<fromChainId:bigint,toChainId:bigint,fromAsset:struct<symbol:string,address:string>,"
    "toAsset:struct<symbol:string,address:string>,routes:array<struct<routeId:string,fromAmount:string,toAmount:string,"
    "usedBridgeNames:array<string>,totalUserTx:int,totalGasFeesInUsd:double,inputValueInUsd:double,"
    "outputValueInUsd:double,receivedValueInUsd:double,isOnlySwapRoute:boolean,"
    "userTxs:array<struct<userTxType:string,routePath:string,userTxIndex:int,"
    "steps:array<struct<type:string,fromAmount:string,toAmount:string,protocol:struct<name:string>>>>>>>>"
)

TOKEN_TOTAL = "struct<usdValue:double,amount:string,symbol:string,decimals:int>"
ADDRESS_TOTAL = "struct<usdValue:double,txs:bigint>"
DAY_STATS_DOCUMENTS = (
    "status_code int, url string, data struct<date:bigint,"
    f"totalTokensDeposited:map<string,{TOKEN_TOTAL}>,totalTokensWithdrawn:map<string,{TOKEN_TOTAL}>,"
    f"totalAddressDeposited:map<string,{ADDRESS_TOTAL}>,totalAddressWithdrawn:map<string,{ADDRESS_TOTAL}>>"
)

TOKEN_REGISTRY_DOCUMENTS = (
    "data map<string,struct<name:string,symbol:string,contract_address:array<struct<contract_address:string,"
    "platform:struct<name:string,coin:struct<id:string,name:string,symbol:string>>>>>>"
)

CHAIN_ASSETS_DOCUMENTS = (
    "chainId bigint, name string, domainId string, confirmations int, "
    "assetId map<string,struct<symbol:string,mainnetEquivalent:string,decimals:int>>"
)

CHAIN_REGISTRY_DOCUMENTS = (
    "id string, name string, chain string, chainId bigint, rpc array<string>, icon struct<publicURL:string>, "
    "nativeCurrency struct<decimals:int,name:string,symbol:string>, explorers array<struct<url:string>>, "
    "status string, faucets array<string>"
)

HOP = "array<struct<chain_id:bigint,amount:string,token:struct<symbol:string,name:string,address:string,decimals:int>>>"
MULTI_HOP_TRANSACTIONS = (
    "id bigint, from_client_id string, from_chain_id bigint, from_tx_hash string, join_chain_id bigint, "
    "join_tx_hash string, to_chain_id bigint, to_tx_hash string, event_type bigint, type bigint, hash string, "
    "state bigint, created_at string, mined_at string, success_at string, from_address string, from_sender string, "
    "duration bigint, to_address string, to_sender string, amounts array<string>, "
    "tokens array<struct<symbol:string,name:string,address:string,decimals:int>>, "
    f"from_route {HOP}, to_route {HOP}, transit_token struct<symbol:string,address:string>, "
    "from_amount_usd double, to_amount_usd double, to_tx_id string, retry_active boolean"
)

CONNECTION_DOCUMENTS = (
    "fromChainId bigint, toChainId bigint, fromTokens array<struct<address:string,symbol:string,decimals:int>>, "
    "toTokens array<struct<address:string,symbol:string,decimals:int>>"
)

STABLECOINS = (
    "id string, name string, symbol string, gecko_id string, pegType string, pegMechanism string, price double, "
    "chains array<string>, chainCirculating map<string,string>"
)

BRIDGE_TRANSFERS = (
    "id string, status string, timestamp bigint, fromChainSymbol string, toChainSymbol string, fromAmount string, "
    "toAmount string, fromTokenAddress string, toTokenAddress string, fromAddress string, toAddress string, "
    "fromGas string, toGas string, relayerFeeInNative string, relayerFeeInTokens string, "
    "sendTransactionHash string, receiveTransactionHash string"
)
