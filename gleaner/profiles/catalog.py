"""Built-in profiles. Everything in this file is a fixed value: the results depend on these texts."""

from __future__ import annotations

from gleaner.functions.urls import CategoryRule, CityStep
from gleaner.profiles.model import (
    CardSpec, ItemSpec, KeyedStateSpec, LinkedDataSpec, SourceProfile, StateTreeSpec,
)

GLOVO = SourceProfile(
    key="glovo",
    name="Glovo",
    domain="glovoapp.com",
    host="glovoapp.com",
    base_url="https://glovoapp.com",
    path_like="/es/%",
    listing_patterns=(
        r"glovoapp\.com/es/[^/]+/[^/]+/restaurantes.*",
        r"glovoapp\.com/es/[^/]+/[^/]+/restaurants.*",
        r"glovoapp\.com/es/[^/]+/[^/]+/category/.*",
        r"glovoapp\.com/es/[^/]+/[^/]+/comida_\d+/?$",
        r"glovoapp\.com/es/[^/]+/[^/]+/comida_\d+/[^/]+/?$",
        r"glovoapp\.com/es/[^/]+/[^/]+/supermercados.*",
    ),
    detail_patterns=(
        r"glovoapp\.com/es/[^/]+/[^/]+/store/.*",
        r"glovoapp\.com/es/[^/]+/[^/]+/[^/]+-[a-z]{3}/$",
    ),
    excluded_paths=("/supermercados", "/parafarmacia", "/tiendas"),
    url_hosts=("glovoapp.com",),
    city_steps=(
        CityStep(
            r"glovoapp\.com/es/[^/]+/([^/]+)",
            strip=(r"(?i)[-_]?restaurantes.*$", r"[-_]?\d+$"),
            separators="-_",
            reject_contains=("domicilio", "delivery", "glovo", "banaketa"),
        ),
    ),
    category_rule=CategoryRule(
        r"/(?:restaurantes|restaurants|menjar|comida)[^/]*/([^/]+)",
        reject=("search-glovo", "gasthof"),
        reject_prefix="search",
    ),
    linked_data=LinkedDataSpec(
        types=("Restaurant", "LocalBusiness", "FoodEstablishment", "Store"),
        percent_rating=True,
        thousands=True,
        geo=True,
        reject_names=("glovo", "glovoapp"),
    ),
    listing_markers=(
        '[data-test-id="category-store-card"]',
        "a.collection-item",
        '[class*="store-card"]:not([class*="store-card-rating"]):not([class*="store-card-info"])',
        '[class*="StoreCard"]',
    ),
    cards=CardSpec(
        cards=(
            '[data-test-id="category-store-card"]',
            "a.collection-item",
            '[class*="StoreCard"], [data-test-id*="store"], a[href*="/es/es/"][href$="/"]',
        ),
        name=('[class*="name"]', '[class*="title"]', "h2", "h3", "h4"),
        skip_unusable=False,
        name_reject=(
            "restaurantes", "ver más", "ver todo", "categoría", "filtro", "ordenar", "buscar", "envío",
            "delivery", "-30%", "-20%", "-10%", "2x1", "1+1", "sort by", "ordenar por", "comida",
            "supermercado", "snacks", "tiendas", "parafarmacia",
        ),
        rating='[class*="rating"]',
        rating_percent=True,
        eta='[class*="eta"], [class*="time"]',
        eta_checked=True,
        image='img[src], img[data-src], [style*="background-image"]',
        image_attrs=("src", "data-src"),
        image_style=True,
    ),
)

UBER_EATS = SourceProfile(
    key="ubereats",
    name="Uber Eats",
    domain="ubereats.com",
    host="www.ubereats.com",
    base_url="https://www.ubereats.com",
    path_like="/es%",
    listing_patterns=(
        r"ubereats\.com/es[^/]*/city/[^/]+$",
        r"ubereats\.com/es[^/]*/city/[^/]+/.*",
        r"ubereats\.com/es[^/]*/brand-city/.*",
    ),
    detail_patterns=(r"ubereats\.com/es[^/]*/store/.*",),
    detail_page="/store/",
    url_hosts=("www.ubereats.com", "ubereats.com"),
    city_steps=(
        CityStep(r"ubereats\.com/es[^/]*/city/([^/\?]+)", strip=(r"-es-[a-z]{2}$",), decode=True),
        CityStep(r"ubereats\.com/city/([^/\?]+)", strip=(r"-es-[a-z]{2}$",), decode=True),
    ),
    linked_data=LinkedDataSpec(
        types=("Restaurant", "LocalBusiness", "FoodEstablishment", "FoodService"),
        locality=True,
        locality_strip=r",\s*Spain$",
        locality_as_city=True,
    ),
    items=ItemSpec(
        patterns=(
            r"window\.__REACT_QUERY_STATE__\s*=\s*(\{.+?\});?\s*(?:</script>|$)",
            r"window\.__PRELOADED_STATE__\s*=\s*(\{.+?\});?\s*(?:</script>|$)",
            r'"stores"\s*:\s*(\[.+?\])',
            r'"feedItems"\s*:\s*(\[.+?\])',
            r'"storesMap"\s*:\s*(\{.+?\})\s*[,}]',
        ),
        containers=("stores", "feedItems", "storesMap", "data", "queries", "state"),
        name=("title", "name", "store.title", "store.name"),
        root="store",
        rating=("rating",),
        rating_value=("ratingValue", "value"),
        rating_count=("ratingCount", "count"),
        address=("address", "location.address"),
        categories=("categories", "cuisines", "tags"),
        category_label=("name", "title"),
        fee=("deliveryFee",),
        eta=("etaRange", "deliveryTime"),
        eta_range=("min", "max"),
        promoted=("isPromoted", "promoted"),
        new=("isNew",),
        latitude=("location.latitude",),
        longitude=("location.longitude",),
        price=("priceBucket", "priceRange"),
        url=("url", "slug"),
        image=("heroImageUrl", "imageUrl"),
    ),
    cards=CardSpec(
        cards=(
            'a[data-testid="store-card"]',
            'div[data-testid="feed-item"]',
            'a[href*="/store/"]',
            'div[class*="StoreCard"]',
            'article[class*="store"]',
        ),
        name=('h3, [class*="StoreTitle"], [class*="name"]',),
        unique_names=False,
        name_any_length=True,
        name_attr="aria-label",
        rating='[class*="rating"], [class*="RatingText"]',
        eta='[class*="time"], [class*="eta"], [class*="EtaText"]',
        categories=('[class*="category"], [class*="cuisine"]',),
        category_split="•",
    ),
)

JUST_EAT = SourceProfile(
    key="justeat",
    name="Just Eat",
    domain="just-eat.es",
    host="www.just-eat.es",
    base_url="https://www.just-eat.es",
    path_like="/%",
    listing_patterns=(r"just-eat\.es/area/\d+-[\w-]+",),
    detail_patterns=(r"just-eat\.es/restaurants-[^?]+",),
    detail_page=r"just-?eat\.es/restaurants-[^/]+",
    url_hosts=("www.just-eat.es", "just-eat.es"),
    city_steps=(
        CityStep(r"just-?eat\.es/area/\d+-([^/\?]+)"),
        CityStep(r"just-?eat\.es/restaurants-[^/]+", none=True),
        CityStep(
            r"just-?eat\.es/([^/\?]+)$",
            reject_equal=(
                "restaurants", "menu", "order", "checkout", "account", "a-domicilio", "es", "en", "blog",
                "repartidor", "info",
            ),
        ),
    ),
    linked_data=LinkedDataSpec(
        types=("Restaurant", "LocalBusiness", "FoodEstablishment", "FoodService"),
        search_page=True,
        geo=True,
        locality=True,
    ),
    keyed_state=KeyedStateSpec(
        marker="__INITIAL_STATE__",
        entities="restaurants",
        categories="restaurantCuisines",
        ratings="ratings",
        fees="deliveryFees",
        etas="etas",
        url_prefix="https://www.just-eat.es/restaurants-",
    ),
    state_tree=StateTreeSpec(
        script_id="__NEXT_DATA__",
        path="$.props.appProps.preloadedState.discovery.restaurantList.restaurantData",
        url_prefix="https://www.just-eat.es/restaurants-",
    ),
    items=ItemSpec(
        patterns=(
            r"window\.__INITIAL_STATE__\s*=\s*(\{.+?\});?\s*(?:</script>|window\.|$)",
            r"window\.je\s*=\s*(\{.+?\});?\s*(?:</script>|$)",
            r'"restaurants"\s*:\s*(\[.+?\])',
            r'"searchResults"\s*:\s*(\[.+?\])',
            r"""data-restaurant-list\s*=\s*['"](.+?)['"]""",
        ),
        containers=("restaurants", "searchResults", "data", "results", "restaurantsList", "entities"),
        name=("name", "restaurantName", "title", "displayName", "DisplayName", "Name"),
        unescape=True,
        rating=("rating", "ratings", "Rating"),
        rating_value=("starRating", "value", "average", "StarRating"),
        rating_count=("count", "total", "Count"),
        count_fallback=("numberOfReviews", "NumberOfReviews"),
        address=("address", "streetAddress", "Address"),
        address_parts=(("firstLine", "FirstLine"), ("city", "City"), ("postcode", "Postcode")),
        neighborhood=("neighborhood", "area"),
        categories=("cuisines", "categories", "tags", "Cuisines", "Categories"),
        category_label=("name", "displayName"),
        delivery=("deliveryInfo", "delivery"),
        fee=("cost", "fee"),
        eta=("etaMinutes", "time"),
        eta_unit=True,
        min_order=("minimumOrder", "minOrderValue"),
        promoted=("isSponsored", "promoted"),
        new=("isNew", "isNewlyOnPlatform"),
        latitude=("latitude", "lat"),
        longitude=("longitude", "lng", "lon"),
        price=("priceCategory",),
        url=("url", "seoName", "urlName"),
        url_prefix="https://www.just-eat.es/restaurants-",
        image=("logoUrl", "image"),
    ),
    cards=CardSpec(
        cards=(
            'div[data-qa="restaurant-card"]',
            '[data-qa^="restaurant-card-"]',
            "section[data-restaurant-id]",
            '[data-test-id="restaurant"]',
            "a[data-restaurant-id]",
            '[class*="RestaurantCard_c-restaurantCard_"]',
            'article[data-test-id="restaurant"]',
            'div[data-test-id="restaurant-card"]',
            'a[data-test-id="restaurant-link"]',
            '[data-test-id="f-restaurant-card--restaurant-card-component"]',
        ),
        name=(
            '[data-qa="restaurant-info-name"]',
            '[data-qa="restaurant-name"]',
            '[class*="restaurant-name"]',
            '[data-test-id="restaurant_name"]',
            '[data-test-id="restaurant-name"]',
            '[class*="restaurantCard-name"]',
            "h2",
            "h3",
            '[class*="name"]',
        ),
        name_from_parent_title=True,
        rating=(
            '[data-qa="restaurant-ratings"], [data-qa="rating"], [data-qa="restaurant-rating"], '
            '[data-test-id="rating"], [class*="rating"], [class*="RatingLabel"]'
        ),
        count='[class*="rating-count"], [class*="RatingCount"]',
        eta=(
            '[data-qa="restaurant-eta"], [data-test-id="eta"], [class*="deliveryTime"], [class*="EtaText"]'
        ),
        categories=(
            '[data-qa="restaurant-cuisine"]',
            '[data-test-id="restaurant-cuisines"]',
            '[data-test-id="cuisines"]',
            '[class*="cuisine"]',
        ),
        category_split=",",
        category_children=True,
        tags='[data-qa="restaurant-tags"]',
        tags_reject=(
            "tarjeta de sellos", "patrocinado", "nuevo", "oferta", "sponsored", "nuevo restaurante",
        ),
        address='[class*="address"], [data-test-id="address"]',
        parent_link=True,
        image='img[data-qa="restaurant-logo"], img[data-test-id="restaurant_logo"], img[src]',
    ),
)

PROFILES = (GLOVO, UBER_EATS, JUST_EAT)


def profile(key: str, profiles: tuple[SourceProfile, ...] = PROFILES) -> SourceProfile:
    for p in profiles:
        if p.key == key:
            return p
    raise ValueError(f"unknown source: {key}")
